"""Corpus operators for language-model data.  Nothing else in the library imports this."""
