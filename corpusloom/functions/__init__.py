"""Column expressions and the few vectorised UDFs: text folds, morphology, vectors, keys."""
