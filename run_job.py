"""Start a job: `spark-submit --py-files ... run_job.py load --help`."""

from pyspark.sql import SparkSession

from tarmac.jobs import arguments, run

if __name__ == "__main__":
    chosen = arguments()
    run(SparkSession.builder.appName(f"tarmac-{chosen.command}").getOrCreate(), chosen)
