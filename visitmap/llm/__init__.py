"""Operators for preparing large text corpora for language-model training."""
