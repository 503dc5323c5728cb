"""DataFrame -> DataFrame operators (extract, daily metrics, windows, calendar, stats, load)."""
