"""Whole plans: the network pipeline, the table loader, and the registered queries."""
