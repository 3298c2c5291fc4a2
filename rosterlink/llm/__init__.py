"""Operators that prepare text for language-model training, each in a module of its own."""
