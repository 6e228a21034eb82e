"""DataFrame -> DataFrame operators (cleaning, joins, aggregation, features, models, metrics)."""
