from tonnage.sources.annotated import read_annotated, read_header
from tonnage.sources.export import read_partitions, write_csv, write_partitions
from tonnage.sources.staging import stage

__all__ = ["read_annotated", "read_header", "read_partitions", "stage", "write_csv", "write_partitions"]
