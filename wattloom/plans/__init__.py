"""The bronze, silver and gold layers as DataFrame plans, and the jobs that store them."""
