"""Composite jobs: cube ETL, refresh, delta split/merge, layout writers."""

from cubelake.plans.csv_folder import transform_csv_folder  # noqa: F401
from cubelake.plans.cube_etl import prepare_cube, prepare_cubes  # noqa: F401
from cubelake.plans.delta_jobs import merge_delta, merge_delta_frames, split_delta  # noqa: F401
from cubelake.plans.layout import publish, push, split_by_key, write_copy, write_year_partitioned  # noqa: F401
from cubelake.plans.refresh import plan_changed, plan_refresh, refresh  # noqa: F401
