"""Operators for corpora that feed language-model training. Nothing else imports this package."""
