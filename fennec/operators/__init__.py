"""DataFrame operators: encoders, TF-IDF, scaling, ensembles, checks."""
