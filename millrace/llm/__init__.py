"""Operators for training data: texts, their tokens, copies, secrets, languages and quality.

Nothing else in the library imports this folder.
"""
