"""loadstar.sources"""
