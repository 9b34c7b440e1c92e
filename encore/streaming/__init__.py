"""encore.streaming"""
