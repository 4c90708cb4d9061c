from silvermill.streaming.ingest import ingest_available, start_ingest, stream_parts
from silvermill.streaming.named import NamedParts, ingest_by_name

__all__ = ["NamedParts", "ingest_available", "ingest_by_name", "start_ingest", "stream_parts"]
