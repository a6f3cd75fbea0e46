"""Run drivers (R1, R2), table settings, and the registered queries."""
