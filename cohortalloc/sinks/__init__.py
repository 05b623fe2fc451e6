"""CSV export and table writers (create, overwrite, append by column name)."""

from cohortalloc.sinks.publish import (  # noqa: F401
    publish,
    publish_table,
    read_published,
)
from cohortalloc.sinks.writers import (  # noqa: F401
    align_to,
    append_table,
    create_table,
    overwrite_table,
    write_csv,
    write_parquet,
)
