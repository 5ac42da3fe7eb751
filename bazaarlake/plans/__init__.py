"""Layer builds, analytic views, dashboard queries and reports."""
