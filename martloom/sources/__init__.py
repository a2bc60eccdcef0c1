"""Where rows come from: stored tables, reference data, change feeds."""
