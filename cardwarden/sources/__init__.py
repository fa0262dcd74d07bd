"""Readers for the five input files, staging tables and the star-schema adapter."""
