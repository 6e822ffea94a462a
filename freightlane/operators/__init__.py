"""DataFrame -> DataFrame operators: conform, keys, joins, profile, reconcile, load."""
