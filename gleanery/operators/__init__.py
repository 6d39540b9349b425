"""operators of the curation engine."""
