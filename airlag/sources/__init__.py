"""Inputs and outputs: derived flights, CSV files, versioned tables."""
