"""loadstar.streaming"""
