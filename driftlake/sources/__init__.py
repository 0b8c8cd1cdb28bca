"""Where rows come from and go to: event landing zone, lake tables, test tables."""
