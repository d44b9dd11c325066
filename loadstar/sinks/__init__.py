"""loadstar.sinks"""
