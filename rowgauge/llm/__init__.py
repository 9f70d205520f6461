"""Operators for preparing training data: text, vectors and conversations at corpus scale."""
