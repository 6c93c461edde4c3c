"""Writers: append, reload, partitioned tables, NDJSON export."""
