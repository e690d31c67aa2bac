"""lodestack.operators"""
