"""Micro-batch form of the run."""
