"""Operators for preparing large-scale training data (nothing else imports this)."""
