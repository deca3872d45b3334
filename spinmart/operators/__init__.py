"""DataFrame-to-DataFrame operators: staging, ranking, pairing, lookups, latest row per key."""
