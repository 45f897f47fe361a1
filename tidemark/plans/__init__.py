"""Plans over many operators: choose processes, keep versions, run a sync."""
