"""lodestack.streaming"""
