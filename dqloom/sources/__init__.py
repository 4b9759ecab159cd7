"""Where tables, rules and snapshots come from, and where reports go."""
