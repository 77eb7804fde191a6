"""Ready-made plans: table contracts, reports, the fact build and the monthly job."""
