"""loadstar.operators"""
