"""Table transforms, feature step, jobs and the driver query catalogue."""
