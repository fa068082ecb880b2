"""Plans: end-to-end jobs and the physical knobs (broadcast checks, checkpoints)."""
