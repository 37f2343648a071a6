"""Inputs and expected results for the driver contract, tests and benchmark."""
