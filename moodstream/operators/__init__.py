"""DataFrame-to-DataFrame building blocks: roll-ups, ranking, unions, joins, term statistics."""
