"""Reports, chart datasets and the batch run that produces them."""
