"""Column contracts and the analytic summary views."""
