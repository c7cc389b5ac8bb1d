from freshet.catalog import (  # noqa: F401  (importing a module registers its queries)
    io_queries,
    layer_queries,
    run_queries,
    scalar_queries,
    selection_queries,
    state_queries,
    stream_queries,
)
from freshet.catalog.base import QUERIES, SQL  # noqa: F401
