"""encore.functions"""
