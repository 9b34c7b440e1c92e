"""encore.sources"""
