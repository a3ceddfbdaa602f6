"""Multi-step jobs: staged intermediates and the table refreshes."""
