"""Outlet-demand analytics on Spark: cleaning, quality checks, spatial features, frontier model, budget allocation."""
