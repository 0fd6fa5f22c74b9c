"""Row-local scoring jobs, their one-pass summaries, masked row alerts and segment rollups, by domain."""
