"""Stages that compose the operators, one function per stage."""
