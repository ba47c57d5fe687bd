"""Writers: the only package that writes (SNK1-SNK8, MAT1)."""

from laketide.sinks.dimension import DimensionTables  # noqa: F401
from laketide.sinks.dimension_log import DimensionLog  # noqa: F401
from laketide.sinks.keyindex import KeyIndex  # noqa: F401
from laketide.sinks.published import PublishedTable  # noqa: F401
from laketide.sinks.write import (  # noqa: F401
    overwrite_partitions, create_table_as, overwrite_partition, append, materialize,
)
