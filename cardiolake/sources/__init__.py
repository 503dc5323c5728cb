"""Sources: export archives and folders, tolerant JSON reading, table scans, API payloads."""
