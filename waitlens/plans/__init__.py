"""Domain pipelines: each is a ``DataFrame -> DataFrame`` function with
keyword-only parameters; the reference's hard-coded dates, sites and code
lists are parameters here."""
