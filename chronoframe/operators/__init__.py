"""Table operators: frame, time series, splits, preparation, models, metrics, ensembles, vectors."""
