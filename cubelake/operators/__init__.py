"""Relational operators built from DataFrame primitives."""

from cubelake.operators.freshness import freshness_diff, latest_release, refresh_plan  # noqa: F401
from cubelake.operators.inference import decide_types, inference_aggregates  # noqa: F401
from cubelake.operators.merge import latest_per_key, merge_values  # noqa: F401
from cubelake.operators.scaling import drop_existing, scale_cube_value, scale_delta_value  # noqa: F401
from cubelake.operators.stats import dataset_sizes, distinct_keys, multiset_difference, status_counts  # noqa: F401
