"""Where rows come from and go to: landing trees, source databases, partitioned parquet tables."""
