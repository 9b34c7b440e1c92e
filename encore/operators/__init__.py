"""encore.operators"""
