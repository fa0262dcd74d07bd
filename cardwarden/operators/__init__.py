"""DataFrame-to-DataFrame steps: joins, cleaning, features, profiles, scores, metrics, checks."""
