"""lodestack.plans"""
