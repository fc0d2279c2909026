"""The layers: staging, intermediate tables, marts, checks and the whole run."""
