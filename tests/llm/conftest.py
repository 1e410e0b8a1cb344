import os
from pathlib import Path

# Python workers import the package from the repository
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH", "")])
