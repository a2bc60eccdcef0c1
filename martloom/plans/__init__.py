"""The warehouse's datasets, from staging to marts."""
