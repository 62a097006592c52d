"""Market-feed lake on Spark: normalise, diagnose, store, certify and replay recorded feeds."""
