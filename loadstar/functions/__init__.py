"""loadstar.functions"""
