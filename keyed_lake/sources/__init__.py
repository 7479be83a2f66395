"""Where rows come from and go to: CSV folders, changelogs, tables."""
