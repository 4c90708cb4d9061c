from silvermill.tables.bucketed import BucketedTable
from silvermill.tables.delta import DeltaSilverTable
from silvermill.tables.profile import TableProfile
from silvermill.tables.silver import SilverTable
from silvermill.tables.staging import StagedBatch, stage

__all__ = ["BucketedTable", "DeltaSilverTable", "SilverTable", "StagedBatch", "TableProfile", "stage"]
