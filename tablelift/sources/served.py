"""A database of the driver's process, served to all machines of a cluster.

An embedded database is seen by its own process only, so tasks elsewhere cannot read it. Here the driver keeps it
in a folder of its own and listens for connections; executors get a JDBC driver (a jar that Spark hands out) whose
connections, statements and results pass each call on. Rows go in blocks, parameters with the batch that they are
of. The address jdbc:derby://host:port/<name> has a random name, without which a connection is refused before
anything of it is read. Dates and times go without a zone, as the database has them."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

#: The JDBC driver's class.
DRIVER = "tablelift.ServedDriver"
#: Compiled by Janino, which Spark has among its jars: without lambdas and inferred types.
SOURCE = r"""
package tablelift;

import java.io.*;
import java.lang.reflect.*;
import java.math.BigDecimal;
import java.net.InetAddress;
import java.net.ServerSocket;
import java.net.Socket;
import java.net.URI;
import java.net.URISyntaxException;
import java.sql.*;
import java.util.*;

public class ServedDriver implements java.sql.Driver {
    public boolean acceptsURL(String url) { return url != null && url.startsWith("jdbc:derby://"); }

    public Connection connect(String url, Properties info) throws SQLException {
        if (!acceptsURL(url)) return null;
        try {
            URI at = new URI(url.substring(5));
            return (Connection) new Channel(at.getHost(), at.getPort(), at.getPath().substring(1), info).proxy(0, "java.sql.Connection");
        } catch (URISyntaxException e) {
            throw new SQLException(e.toString(), "08001");
        } catch (IOException e) {
            throw new SQLException("no connection to " + url.substring(0, url.lastIndexOf('/')) + ": " + e, "08001");
        }
    }

    /** Serves the embedded database of this address; the port. */
    public static int serve(String host, String address, String name) throws Exception {
        embedded(address + ";create=true", new Properties()).close();
        ServerSocket server = new ServerSocket(0, 200, InetAddress.getByName(host));
        new Listener(server, address, name).start();
        return server.getLocalPort();
    }

    static Connection embedded(String address, Properties info) throws Exception {
        return ((java.sql.Driver) Class.forName("org.apache.derby.iapi.jdbc.AutoloadedDriver").getConstructor(new Class[0]).newInstance(new Object[0])).connect(address, info);
    }

    public DriverPropertyInfo[] getPropertyInfo(String url, Properties info) { return new DriverPropertyInfo[0]; }
    public int getMajorVersion() { return 1; }
    public int getMinorVersion() { return 0; }
    public boolean jdbcCompliant() { return false; }
    public java.util.logging.Logger getParentLogger() { return null; }
}

class Plain {
    /** A value as it is sent: without a zone, and with the contents of large objects. */
    static Object sent(Object x) throws SQLException {
        if (x instanceof java.sql.Date) return ((java.sql.Date) x).toLocalDate();
        if (x instanceof Timestamp) return ((Timestamp) x).toLocalDateTime();
        if (x instanceof Time) return ((Time) x).toLocalTime();
        if (x instanceof Clob) return ((Clob) x).getSubString(1L, (int) ((Clob) x).length());
        if (x instanceof Blob) return ((Blob) x).getBytes(1L, (int) ((Blob) x).length());
        return x;
    }

    static Object read(Object x) {
        if (x instanceof java.time.LocalDate) return java.sql.Date.valueOf((java.time.LocalDate) x);
        if (x instanceof java.time.LocalDateTime) return Timestamp.valueOf((java.time.LocalDateTime) x);
        if (x instanceof java.time.LocalTime) return Time.valueOf((java.time.LocalTime) x);
        return x;
    }
}

class Channel {
    final Socket socket;
    final ObjectOutputStream out;
    final ObjectInputStream in;
    final List pending = new ArrayList();

    Channel(String host, int port, String name, Properties info) throws IOException {
        socket = new Socket(host, port);
        socket.setTcpNoDelay(true);
        DataOutputStream first = new DataOutputStream(socket.getOutputStream());
        first.writeUTF(name);
        first.writeUTF(info.getProperty("user", ""));
        first.writeUTF(info.getProperty("password", ""));
        first.flush();
        out = new ObjectOutputStream(new BufferedOutputStream(socket.getOutputStream(), 1 << 16));
        out.flush();
        in = new ObjectInputStream(new BufferedInputStream(socket.getInputStream(), 1 << 16));
    }

    Object proxy(int id, String kind) throws SQLException {
        try {
            Class face = Class.forName(kind);
            return Proxy.newProxyInstance(Channel.class.getClassLoader(), new Class[] {face}, new Handler(this, id, kind));
        } catch (ClassNotFoundException e) {
            throw new SQLException(e.toString());
        }
    }

    synchronized Object call(Object[] one) throws SQLException {
        pending.add(one);
        Object[] calls = pending.toArray();
        pending.clear();
        Object[] reply;
        try {
            out.writeObject(calls);
            out.reset();
            out.flush();
            reply = (Object[]) in.readObject();
        } catch (IOException e) {
            throw new SQLException("connection lost: " + e, "08006");
        } catch (ClassNotFoundException e) {
            throw new SQLException(e.toString(), "08006");
        }
        if ("error".equals(reply[0])) throw (SQLException) reply[1];
        if ("value".equals(reply[0])) return Plain.read(reply[1]);
        return proxy(((Integer) reply[1]).intValue(), (String) reply[0]);
    }

    synchronized void later(Object[] one) { pending.add(one); }
}

class Handler implements InvocationHandler {
    final Channel channel;
    final Integer id;
    final String kind;
    final Map kinds = new HashMap();
    Object[] rows = new Object[0];
    int at = -1;
    boolean more = true, closed = false;
    Object last;
    /** Of a statement: parameters not sent yet (setters by place, types of nulls, values), and rows of a batch. */
    String[] setters = new String[0];
    Integer[] nulls = new Integer[0];
    Object[] values = new Object[0];
    boolean dirty = false;
    List batch = new ArrayList();

    Handler(Channel channel, int id, String kind) {
        this.channel = channel;
        this.id = Integer.valueOf(id);
        this.kind = kind;
    }

    public Object invoke(Object self, Method m, Object[] args) throws Throwable {
        String name = m.getName();
        int n = args == null ? 0 : args.length;
        if (m.getDeclaringClass() == Object.class) {
            if (name.equals("equals")) return Boolean.valueOf(self == args[0]);
            if (name.equals("hashCode")) return Integer.valueOf(System.identityHashCode(self));
            return kind + " " + id;
        }
        if (name.equals("isClosed") && closed) return Boolean.TRUE;
        if (name.equals("close")) {
            if (closed) return null;
            closed = true;
        }
        if (kind.equals("java.sql.ResultSet")) {
            if (name.equals("next")) return Boolean.valueOf(next());
            if (name.equals("wasNull")) return Boolean.valueOf(last == null);
            if (n == 1 && name.startsWith("get") && args[0] instanceof Integer) return value(name.substring(3), ((Integer) args[0]).intValue());
        }
        if (kind.equals("java.sql.PreparedStatement")) {
            if (n == 2 && name.startsWith("set") && args[0] instanceof Integer) {
                set(name, ((Integer) args[0]).intValue() - 1, args[1]);
                return null;
            }
            if (n == 0 && name.equals("addBatch")) {
                batch.add(values.clone());
                dirty = false;
                return null;
            }
            if (dirty || !batch.isEmpty()) {
                channel.later(new Object[] {id, kind, "#batch", null, new Object[] {setters.clone(), nulls.clone(), batch.toArray(), dirty ? values.clone() : null}});
                batch.clear();
                dirty = false;
            }
        }
        Object[] given = new Object[n];
        for (int i = 0; i < n; i++) given[i] = Plain.sent(args[i]);
        Class[] types = (Class[]) kinds.get(m);
        if (types == null) kinds.put(m, types = m.getParameterTypes());
        Object[] one = new Object[] {id, kind, name, types, given};
        Object out;
        try {
            out = channel.call(one);
        } finally {
            if (name.equals("close") && id.intValue() == 0) channel.socket.close();
        }
        return out;
    }

    void set(String name, int i, Object x) throws SQLException {
        if (i >= values.length) {
            setters = (String[]) Arrays.copyOf(setters, i + 1);
            nulls = (Integer[]) Arrays.copyOf(nulls, i + 1);
            values = Arrays.copyOf(values, i + 1);
        }
        if (name.equals("setNull")) {
            nulls[i] = (Integer) x;
            values[i] = null;
        } else {
            setters[i] = name;
            values[i] = Plain.sent(x);
        }
        dirty = true;
    }

    boolean next() throws SQLException {
        if (++at < rows.length) return true;
        if (!more) return false;
        Object[] block = (Object[]) channel.call(new Object[] {id, kind, "#rows", null, null});
        more = ((Boolean) block[0]).booleanValue();
        rows = (Object[]) block[1];
        at = 0;
        return rows.length > 0;
    }

    Object value(String type, int i) throws SQLException {
        Object x = last = Plain.read(((Object[]) rows[at])[i - 1]);
        if (type.equals("Boolean")) return Boolean.valueOf(x instanceof Boolean ? ((Boolean) x).booleanValue() : x != null && number(x).signum() != 0);
        if (type.equals("Int")) return Integer.valueOf(x == null ? 0 : number(x).intValue());
        if (type.equals("Long")) return Long.valueOf(x == null ? 0L : x instanceof Long ? ((Long) x).longValue() : number(x).longValue());
        if (type.equals("Short")) return Short.valueOf(x == null ? (short) 0 : number(x).shortValue());
        if (type.equals("Byte")) return Byte.valueOf(x == null ? (byte) 0 : number(x).byteValue());
        if (type.equals("Double")) return Double.valueOf(x == null ? 0.0 : x instanceof Number ? ((Number) x).doubleValue() : Double.parseDouble(x.toString()));
        if (type.equals("Float")) return Float.valueOf(x == null ? 0.0f : x instanceof Number ? ((Number) x).floatValue() : Float.parseFloat(x.toString()));
        if (x == null) return null;
        if (type.equals("String") || type.equals("NString")) return x.toString();
        if (type.equals("BigDecimal")) return number(x);
        if (type.equals("Date") && x instanceof Timestamp) return java.sql.Date.valueOf(((Timestamp) x).toLocalDateTime().toLocalDate());
        if (type.equals("Timestamp") && x instanceof java.sql.Date) return Timestamp.valueOf(((java.sql.Date) x).toLocalDate().atStartOfDay());
        if (type.equals("Object") || type.equals("Date") || type.equals("Timestamp") || type.equals("Time") || type.equals("Bytes")) return x;
        throw new SQLFeatureNotSupportedException("get" + type);
    }

    static BigDecimal number(Object x) { return x instanceof BigDecimal ? (BigDecimal) x : new BigDecimal(x.toString()); }
}

class Listener extends Thread {
    final ServerSocket server;
    final String address, name;

    Listener(ServerSocket server, String address, String name) {
        this.server = server;
        this.address = address;
        this.name = name;
        setDaemon(true);
    }

    public void run() {
        try {
            while (true) new Served(server.accept(), address, name).start();
        } catch (IOException e) {
            // closed
        }
    }
}

class Served extends Thread {
    final Socket socket;
    final String address, name;
    final Map objects = new HashMap(), methods = new HashMap();
    int count = 0;

    Served(Socket socket, String address, String name) {
        this.socket = socket;
        this.address = address;
        this.name = name;
        setDaemon(true);
    }

    public void run() {
        Connection base = null;
        try {
            socket.setTcpNoDelay(true);
            DataInputStream first = new DataInputStream(socket.getInputStream());
            if (!first.readUTF().equals(name)) return;
            Properties info = new Properties();
            String user = first.readUTF(), password = first.readUTF();
            if (!user.isEmpty()) info.setProperty("user", user);
            if (!password.isEmpty()) info.setProperty("password", password);
            ObjectOutputStream out = new ObjectOutputStream(new BufferedOutputStream(socket.getOutputStream(), 1 << 16));
            out.flush();
            ObjectInputStream in = new ObjectInputStream(new BufferedInputStream(socket.getInputStream(), 1 << 16));
            while (true) {
                Object[] calls = (Object[]) in.readObject();
                Object[] reply = null;
                try {
                    if (base == null) {
                        base = ServedDriver.embedded(address, info);
                        objects.put(Integer.valueOf(0), base);
                    }
                    for (int i = 0; i < calls.length; i++) reply = one((Object[]) calls[i]);
                } catch (InvocationTargetException e) {
                    reply = new Object[] {"error", failure(e.getTargetException())};
                } catch (Exception e) {
                    reply = new Object[] {"error", failure(e)};
                }
                out.writeObject(reply);
                out.reset();
                out.flush();
            }
        } catch (Exception e) {
            // the other side has gone
        } finally {
            try {
                if (base != null && !base.isClosed()) {
                    if (!base.getAutoCommit()) base.rollback();
                    base.close();
                }
            } catch (SQLException e) {
            }
            try {
                socket.close();
            } catch (IOException e) {
            }
        }
    }

    /** The error with its state and message: its class may not be known on the other side. */
    static SQLException failure(Throwable e) {
        SQLException known = e instanceof SQLException ? (SQLException) e : null;
        if (known instanceof BatchUpdateException && known.getNextException() != null) known = known.getNextException();
        if (known == null) return new SQLException(e.toString());
        return known instanceof SQLSyntaxErrorException ? new SQLSyntaxErrorException(known.getMessage(), known.getSQLState(), known.getErrorCode()) : new SQLException(known.getMessage(), known.getSQLState(), known.getErrorCode());
    }

    Object[] one(Object[] call) throws Exception {
        Object target = objects.get(call[0]);
        String kind = (String) call[1], name = (String) call[2];
        if (target == null) throw new SQLException("closed", "08003");
        if (name.equals("#rows")) return new Object[] {"value", rows((ResultSet) target)};
        if (name.equals("#batch")) {
            Object[] given = (Object[]) call[4];
            PreparedStatement to = (PreparedStatement) target;
            Object[] rows = (Object[]) given[2];
            for (int i = 0; i < rows.length; i++) {
                set(to, (String[]) given[0], (Integer[]) given[1], (Object[]) rows[i]);
                to.addBatch();
            }
            if (given[3] != null) set(to, (String[]) given[0], (Integer[]) given[1], (Object[]) given[3]);
            return null;
        }
        Class[] types = (Class[]) call[3];
        String key = kind + name + Arrays.toString(types);
        Method m = (Method) methods.get(key);
        if (m == null) methods.put(key, m = Class.forName(kind).getMethod(name, types));
        Object[] args = (Object[]) call[4];
        for (int i = 0; i < args.length; i++) args[i] = Plain.read(args[i]);
        Object out = m.invoke(target, args);
        if (name.equals("close") && ((Integer) call[0]).intValue() > 0) objects.remove(call[0]);
        String face = null;
        if (out instanceof ResultSet) face = "java.sql.ResultSet";
        else if (out instanceof PreparedStatement) face = "java.sql.PreparedStatement";
        else if (out instanceof Statement) face = "java.sql.Statement";
        else if (out instanceof Connection) face = "java.sql.Connection";
        else if (out instanceof DatabaseMetaData) face = "java.sql.DatabaseMetaData";
        else if (out instanceof ResultSetMetaData) face = "java.sql.ResultSetMetaData";
        else if (out instanceof ParameterMetaData) face = "java.sql.ParameterMetaData";
        if (face == null) return new Object[] {"value", out instanceof Serializable || out == null ? Plain.sent(out) : out.toString()};
        objects.put(Integer.valueOf(++count), out);
        return new Object[] {face, Integer.valueOf(count)};
    }

    static void set(PreparedStatement to, String[] setters, Integer[] nulls, Object[] values) throws SQLException {
        for (int i = 0; i < values.length; i++) {
            Object x = Plain.read(values[i]);
            String how = setters[i];
            if (x == null) to.setNull(i + 1, nulls[i] == null ? Types.VARCHAR : nulls[i].intValue());
            else if (how.equals("setString")) to.setString(i + 1, (String) x);
            else if (how.equals("setInt")) to.setInt(i + 1, ((Integer) x).intValue());
            else if (how.equals("setLong")) to.setLong(i + 1, ((Long) x).longValue());
            else if (how.equals("setDouble")) to.setDouble(i + 1, ((Double) x).doubleValue());
            else if (how.equals("setFloat")) to.setFloat(i + 1, ((Float) x).floatValue());
            else if (how.equals("setBoolean")) to.setBoolean(i + 1, ((Boolean) x).booleanValue());
            else if (how.equals("setShort")) to.setShort(i + 1, ((Short) x).shortValue());
            else if (how.equals("setByte")) to.setByte(i + 1, ((Byte) x).byteValue());
            else if (how.equals("setBytes")) to.setBytes(i + 1, (byte[]) x);
            else if (how.equals("setBigDecimal")) to.setBigDecimal(i + 1, (BigDecimal) x);
            else if (how.equals("setDate")) to.setDate(i + 1, (java.sql.Date) x);
            else if (how.equals("setTimestamp")) to.setTimestamp(i + 1, (Timestamp) x);
            else if (how.equals("setTime")) to.setTime(i + 1, (Time) x);
            else if (how.equals("setObject")) to.setObject(i + 1, x);
            else throw new SQLFeatureNotSupportedException(how);
        }
    }

    static Object[] rows(ResultSet from) throws SQLException {
        List found = new ArrayList();
        int n = from.getMetaData().getColumnCount();
        boolean more = true;
        while (found.size() < 1000 && (more = from.next())) {
            Object[] row = new Object[n];
            for (int i = 0; i < n; i++) row[i] = Plain.sent(from.getObject(i + 1));
            found.add(row);
        }
        return new Object[] {Boolean.valueOf(more), found.toArray()};
    }
}
"""

#: The jar, its class loader in the driver, and the applications whose executors have it.
_made: dict[str, object] = {}


def _compiled(jvm) -> str:
    """The jar of the classes, made once by this process."""
    if "jar" not in _made:
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(SOURCE)
        folder = tempfile.mkdtemp(prefix="tablelift-driver-")
        atexit.register(shutil.rmtree, folder, True)
        path = f"{folder}/tablelift-served.jar"
        with zipfile.ZipFile(path, "w") as z:
            found = compiler.getBytecodes()
            for name in list(found.keySet()):
                z.writestr(name.replace(".", "/") + ".class", bytes(found[name]))
        _made["jar"] = path
    return _made["jar"]


def known(spark) -> None:
    """Make the driver's class known to this thread and to the executors."""
    sc = spark.sparkContext
    jvm, jar = sc._jvm, _compiled(sc._jvm)
    thread = jvm.java.lang.Thread.currentThread()
    if "loader" not in _made:
        urls = sc._gateway.new_array(jvm.java.net.URL, 1)
        urls[0] = jvm.java.io.File(jar).toURI().toURL()
        _made["loader"] = jvm.java.net.URLClassLoader(urls, thread.getContextClassLoader())
    thread.setContextClassLoader(_made["loader"])
    if _made.get("application") != sc.applicationId:
        sc._jsc.addJar(jar)
        _made["application"] = sc.applicationId


def serve(spark) -> str:
    """The address of a new, empty database."""
    known(spark)
    sc, name = spark.sparkContext, f"tablelift{uuid.uuid4().hex}"
    jvm, folder = sc._jvm, tempfile.mkdtemp(prefix="tablelift-database-")
    atexit.register(shutil.rmtree, folder, True)
    jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
    jvm.java.lang.System.setProperty("derby.system.durability", "test")  # the database ends with this process
    host = sc.getConf().get("spark.driver.host")
    kinds, values = (sc._gateway.new_array(k, 3) for k in (jvm.java.lang.Class, jvm.java.lang.Object))
    for i, v in enumerate((sc.getConf().get("spark.driver.bindAddress", host), f"jdbc:derby:directory:{folder}/{name}", name)):
        kinds[i], values[i] = jvm.java.lang.Class.forName("java.lang.String"), v
    served = jvm.java.lang.Class.forName(DRIVER, True, _made["loader"])
    return f"jdbc:derby://{host}:{served.getMethod('serve', kinds).invoke(None, values)}/{name}"
