"""Operators of a pipeline for language-model training data. Nothing else imports this."""
