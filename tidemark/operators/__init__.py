"""Relational operators of the three workloads, as DataFrame -> DataFrame functions."""
