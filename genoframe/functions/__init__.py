"""genoframe.functions"""
