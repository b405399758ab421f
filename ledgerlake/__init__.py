"""ledgerlake: a Spark-native engine for cloud-billing and CRM record pipelines.

Every operator is a function ``DataFrame -> DataFrame`` (chain them with
``DataFrame.transform``) built from Spark SQL built-ins, so Catalyst plans the
whole pipeline: projections fuse into one whole-stage-codegen span, filters
reach the Parquet scan, the account lookup is a size-checked broadcast join,
and the only shuffles are the aggregations and the batch numbering.
"""

from ledgerlake.params import RunContext

__all__ = ["RunContext"]
__version__ = "0.1.0"
