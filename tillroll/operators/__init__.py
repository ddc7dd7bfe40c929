"""DataFrame-level operators: cleaning, global ranking, star build, integrity checks."""
