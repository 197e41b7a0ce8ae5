"""Where rows come from and go to: captured feeds, topics, the lake, tables."""
