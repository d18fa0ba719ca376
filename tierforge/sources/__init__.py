from tierforge.sources.ingest import IngestEntry, ingest_all
from tierforge.sources.ledger import land_new, read_landed, read_ledger, vacuum_landed
from tierforge.sources.raw_csv import CORRUPT, read_raw_csv
from tierforge.sources.tables import read_layer, read_table_or_path

__all__ = [
    "CORRUPT",
    "IngestEntry",
    "ingest_all",
    "land_new",
    "read_landed",
    "read_layer",
    "read_ledger",
    "read_raw_csv",
    "read_table_or_path",
    "vacuum_landed",
]
