"""DataFrame-in, DataFrame-out operators: joins, look-ups, reports, rankings, updates."""
