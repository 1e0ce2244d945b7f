"""strata.sources"""
