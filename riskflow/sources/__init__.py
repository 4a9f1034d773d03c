from .events import raw_events, transactions_from_events
from .raw import bronze_projection, read_raw, read_raw_stream
from .tables import read_predictions, read_table

__all__ = ["raw_events", "transactions_from_events", "bronze_projection", "read_raw",
           "read_raw_stream", "read_predictions", "read_table"]
