"""Sources: catalogs, registry, delta files, cube CSVs, archives, JSON rows, lake."""

from cubelake.sources.archives import read_envelopes, unzip_to_landing  # noqa: F401
from cubelake.sources.catalog import catalog_projection, read_catalog, read_changed, read_changed_on  # noqa: F401
from cubelake.sources.cube_csv import list_files, read_cube_text, read_headers  # noqa: F401
from cubelake.sources.delta_csv import read_delta  # noqa: F401
from cubelake.sources.json_rows import read_json_rows  # noqa: F401
from cubelake.sources.lake import query_cube, read_cube, read_path, register_cube  # noqa: F401
from cubelake.sources.registry import (  # noqa: F401
    append_registry,
    ensure_registry,
    latest_registry,
    read_registry,
    registry_rows,
)
