"""Operators for preparing training corpora, as DataFrame -> DataFrame functions."""
