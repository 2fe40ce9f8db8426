"""Contracts of the incident, area and weather tables, and the jobs made from the operators."""
