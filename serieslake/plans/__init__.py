"""Multi-step plans: the currency fair-value model from catalog to signals."""
