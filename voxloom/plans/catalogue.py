"""All registered queries. Importing the modules registers them."""

from voxloom.plans import (metric_queries, model_queries, sampling_queries,  # noqa: F401
                           source_queries, text_queries)
from voxloom.plans.registry import QUERIES, SQL  # noqa: F401
