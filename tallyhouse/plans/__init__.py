"""The named analytics of the four areas, the jobs that load them, and backfills."""
