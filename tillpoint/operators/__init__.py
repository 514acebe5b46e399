"""Distributed building blocks the analyses share."""
