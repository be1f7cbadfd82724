"""Column expressions and the distributed ordering / skew helpers the operators share."""
