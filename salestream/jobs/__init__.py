"""Entry points for spark-submit. All addresses and paths come as arguments."""
