"""From a census, policies, tags and a fill value to a flat layout and its jobs."""
