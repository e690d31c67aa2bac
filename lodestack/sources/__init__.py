"""lodestack.sources"""
