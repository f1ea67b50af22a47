from quayside.streaming.ingest import ingest_batch, start_ingest
from quayside.streaming.liveness import read_liveness, start_liveness

__all__ = ["ingest_batch", "read_liveness", "start_ingest", "start_liveness"]
