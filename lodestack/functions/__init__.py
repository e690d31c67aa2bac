"""lodestack.functions"""
