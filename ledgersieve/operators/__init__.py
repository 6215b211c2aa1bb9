"""DataFrame-to-DataFrame steps of the flow; all lazy, none triggers a job."""
