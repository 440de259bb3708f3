from .ingest import (AVAILABLE_NOW, await_done, parse_orders, rejected_messages, start_append,
                     start_insert_only, start_snapshot, start_upsert)

__all__ = ["AVAILABLE_NOW", "await_done", "parse_orders", "rejected_messages", "start_append",
           "start_insert_only", "start_snapshot", "start_upsert"]
