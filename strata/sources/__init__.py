"""Where rows come from: files, stored tables, message logs."""
