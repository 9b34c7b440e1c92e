"""encore.plans"""
