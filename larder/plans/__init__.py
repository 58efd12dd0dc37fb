"""Whole stages, each from stored tables to stored tables."""
