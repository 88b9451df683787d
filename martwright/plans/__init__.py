"""The models: staging, silver, gold, reports, checks and the build that ties them."""
