"""DataFrame operators: keep-latest, upsert, period grains, month-over-month, data checks."""
