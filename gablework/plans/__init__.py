"""Whole jobs put together from the operators: model recipes, tuning, cleaning chains."""
