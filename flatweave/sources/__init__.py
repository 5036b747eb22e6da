"""Inputs, the lists-intact copy, the stored census and flat CSV output."""
