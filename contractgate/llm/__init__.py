"""Operators for preparing training data (see README, section "Training-data operators")."""
