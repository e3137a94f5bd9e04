"""Table operators: cleaning, aggregation, ordering, joins, folds, encoding, blending."""
