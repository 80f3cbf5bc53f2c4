"""Property-market analytics on Spark: loaders, staging, marts, panels, backtests."""
