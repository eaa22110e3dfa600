"""Plans: publishing table versions and composing a full load run."""
