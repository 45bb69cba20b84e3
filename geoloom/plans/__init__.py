"""geoloom.plans"""
