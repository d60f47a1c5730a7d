"""Ready-made reports and the manifest-driven run."""
